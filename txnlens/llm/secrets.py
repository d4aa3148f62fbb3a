"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Each text is searched for the base kinds and for opaque strings. The values found are counted over the
whole corpus by distinct owners and repositories: a value that many owners have is a copied
example; one that few have, and that is no placeholder, looks live. Base spans always stay; an
opaque string becomes a span if it looks live and overlaps no base span.

Spark gives the texts of matches but not their places: the pieces between the matches and the
matches themselves, put end to end, are the text, so a running sum of their lengths is the place.
That sum is taken per text and kind. Occurrences are counted per value, owner and repository first,
so a value copied everywhere costs as many rows as it has repositories.

Edge cases: null text is empty; a text without candidates has zero counts, empty ``spans`` and the hash of
the empty string. Null owners and repositories count as one more owner and repository. Rows that repeat
an id are searched one by one. An empty table gives an empty result; columns other than ``doc_id``,
``text``, the owner and the repository are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.llm.common import table, whole_text, written

# The searched patterns in the order of their kinds, and the group that holds the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("opaque", OPAQUE, 0))
BASE_KINDS = 3

#: Owners from which on a value counts as a copied example.
EXAMPLE_OWNERS = 3
#: Distinct characters that a live value has at least.
LIVE_CHARS = 8
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your|test|xxxx|0000|1234"


def _matches(pattern: str, group: int) -> Column:
    """For each match the length of the text since the last one, its own length and its value."""
    text, regex = F.col("_text"), F.lit(pattern)
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    values = F.regexp_extract_all(text, regex, F.lit(group)) if group else found
    zipped = F.arrays_zip(pieces.alias("gap"), found.alias("all"), values.alias("value"))
    spans = F.transform(
        F.slice(zipped, 1, F.size(found)),
        lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["all"]).alias("size"), m["value"].alias("value")),
    )
    return F.when(text.rlike(pattern), spans)


def _passes(kind: Column, value: Column) -> Column:
    """The matches that count: long enough values, and opaque strings of mixed characters."""
    mixed = value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    return F.when(kind == 1, F.length(value) >= 12).when(kind == 4, mixed).otherwise(F.lit(True))


def candidates(docs: DataFrame, owner: str, repository: Column) -> DataFrame:
    """One row per document with the matches of each kind: written out, as it is read several times."""
    text = docs.select("doc_id", F.col(owner).alias("_owner"), repository.alias("_repository"), whole_text().alias("_text"))
    found = [_matches(pattern, group).alias(f"_kind{i}") for i, (_, pattern, group) in enumerate(KINDS, 1)]
    row = F.monotonically_increasing_id().alias("_row")
    return written(text.select(row, "doc_id", "_owner", "_repository", *found), "secret-candidates")


def spans(found: DataFrame) -> DataFrame:
    """One row per candidate: document, kind, place, hash of the value and whether it looks like a secret."""
    each = None
    for i in range(1, len(KINDS) + 1):
        kind = found.where(f"_kind{i} IS NOT NULL").select(
            "_row", "_owner", "_repository", F.lit(i).alias("_kind"), F.posexplode(f"_kind{i}").alias("_place", "_match")
        )
        each = kind if each is None else each.unionByName(kind)
    before = W.partitionBy("_row", "_kind").orderBy("_place").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("_match.gap") + F.col("_match.size")).over(before)
    value = F.col("_match.value")
    placed = each.select(
        "_row", "_owner", "_repository", "_kind", value.alias("_value"),
        (end - F.col("_match.size")).cast("bigint").alias("_start"), end.cast("bigint").alias("_end"),
    ).where(_passes(F.col("_kind"), F.col("_value")))
    varied = F.size(F.array_distinct(F.split("_value", ""))) >= LIVE_CHARS
    return placed.select(
        "_row", "_owner", "_repository", "_kind", "_start", "_end",
        F.sha2("_value", 256).alias("_hash"), (varied & ~F.col("_value").rlike(PLACEHOLDER)).alias("_secretive"),
    )


def ownership(placed: DataFrame) -> DataFrame:
    """Per value: in how many repositories and with how many owners it stands."""
    stands = placed.groupBy("_hash", "_owner", "_repository").agg(F.count("*").alias("_n"))
    owners = stands.groupBy("_hash", "_owner").agg(F.count("*").alias("_repositories"))
    return owners.groupBy("_hash").agg(F.sum("_repositories").alias("_repositories"), F.count("*").alias("_owners"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: Column | None = None) -> DataFrame:
    """Per row of ``docs``: counts per kind, the digest of the base spans and all spans."""
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    found = candidates(docs, owner, repository)
    placed = written(spans(found), "secret-spans")
    owned = written(ownership(placed), "secret-owners")
    told = placed.join(owned, "_hash")
    example = F.col("_owners") >= EXAMPLE_OWNERS
    live = ~example & F.col("_secretive")

    # A base span that overlaps an opaque string starts before the string's end and ends after its start.
    by_start = W.partitionBy("_row").orderBy("_start", "_kind")
    base = F.col("_kind") <= BASE_KINDS
    ended = F.max(F.when(base, F.col("_end"))).over(by_start.rowsBetween(W.unboundedPreceding, -1))
    next_start = F.min(F.when(base, F.col("_start"))).over(by_start.rowsBetween(1, W.unboundedFollowing))
    free = (F.coalesce(ended, F.lit(0)) <= F.col("_start")) & (F.coalesce(next_start, F.col("_end")) >= F.col("_end"))
    told = told.select("_row", "_kind", "_start", "_end", "_owners", "_repositories", base.alias("_base"),
                       live.alias("_live"), example.alias("_example"), free.alias("_free"))
    told = told.where("_base OR (_live AND _free)")
    name = F.element_at(F.array(*(F.lit(k) for k, _, _ in KINDS)), F.col("_kind"))
    text = F.concat_ws(":", name, F.col("_start").cast("string"), F.col("_end").cast("string"))
    item = F.struct("_start", "_kind", text.alias("text"))

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(items), lambda x: x["text"]), ",")

    def count(which: Column) -> Column:
        return F.count(F.when(which, 1))

    by_row = told.groupBy("_row").agg(
        *(count(F.col("_kind") == i).alias(f"n_{k}") for i, (k, _, _) in enumerate(KINDS, 1)),
        count(F.col("_live")).alias("n_live"),
        count(F.col("_example")).alias("n_example"),
        F.max("_owners").alias("max_owners"),
        F.max("_repositories").alias("max_repositories"),
        joined(F.collect_list(F.when(F.col("_base"), item))).alias("_base_spans"),
        joined(F.collect_list(item)).alias("spans"),
    )
    rows = found.select("_row", "doc_id").join(by_row, "_row", "left")
    counts = [f"n_{k}" for k, _, _ in KINDS] + ["n_live", "n_example", "max_owners", "max_repositories"]
    return rows.select(
        "doc_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.sha2(F.coalesce("_base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def op5_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def matches(i: int, pattern: str, group: int) -> str:
        quoted = "'" + pattern.replace("'", "''") + "'"
        return f"""
  SELECT r, o, p, {i} AS kind, unnest(list_transform(string_split_regex(t, {quoted}), lambda x: length(x))) AS gap,
    unnest(list_transform(regexp_extract_all(t, {quoted}, 0), lambda x: length(x))) AS size,
    unnest(regexp_extract_all(t, {quoted}, {group})) AS v,
    unnest(range(1, 1 + len(regexp_extract_all(t, {quoted}, 0)))) AS place
  FROM d WHERE regexp_matches(t, {quoted})"""

    each = " UNION ALL ".join(matches(i, pattern, group) for i, (_, pattern, group) in enumerate(KINDS, 1))
    names = ", ".join(f"'{k}'" for k, _, _ in KINDS)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS o, concat_ws('/', source, lang) AS p, coalesce(text, '') AS t FROM documents
), m AS ({each}),
placed AS (
  SELECT r, o, p, kind, v, e - size AS s, e FROM (
    SELECT *, sum(gap + size) OVER (PARTITION BY r, kind ORDER BY place) AS e FROM m WHERE place IS NOT NULL)
  WHERE CASE kind WHEN 1 THEN length(v) >= 12
    WHEN 4 THEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') ELSE true END
), owned AS (
  SELECT v, count(DISTINCT coalesce(o, chr(0))) AS owners, count(DISTINCT coalesce(o, chr(0)) || chr(1) || p) AS repositories
  FROM placed GROUP BY v
), told AS (
  SELECT r, kind, s, e, owners, repositories, kind <= {BASE_KINDS} AS base, owners >= {EXAMPLE_OWNERS} AS example,
    owners < {EXAMPLE_OWNERS} AND len(list_distinct(string_split(v, ''))) >= {LIVE_CHARS}
      AND NOT regexp_matches(v, '{PLACEHOLDER}') AS live,
    coalesce(max(CASE WHEN kind <= {BASE_KINDS} THEN e END) OVER (PARTITION BY r ORDER BY s, kind
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= s
    AND coalesce(min(CASE WHEN kind <= {BASE_KINDS} THEN s END) OVER (PARTITION BY r ORDER BY s, kind
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), e) >= e AS free
  FROM placed JOIN owned USING (v)
), by_row AS (
  SELECT r, count(*) FILTER (kind = 1) AS n_assign, count(*) FILTER (kind = 2) AS n_access, count(*) FILTER (kind = 3) AS n_hex,
    count(*) FILTER (kind = 4) AS n_opaque, count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example,
    max(owners) AS max_owners, max(repositories) AS max_repositories,
    string_agg([{names}][kind] || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, kind) FILTER (base) AS base_spans,
    string_agg([{names}][kind] || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, kind) AS spans
  FROM told WHERE base OR (live AND free) GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(n_opaque, 0) AS n_opaque, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(max_owners, 0) AS max_owners, coalesce(max_repositories, 0) AS max_repositories,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_row USING (r)
"""


OP5_SQL = _sql()

ENTRIES = {"op5_secret_ownership": (op5_secret_ownership, OP5_SQL)}
