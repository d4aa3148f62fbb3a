"""Feature pipeline, classifiers, evaluation, artefacts and scoring."""
