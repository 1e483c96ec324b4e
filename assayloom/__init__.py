"""assayloom: curation, retrieval, scoring and graph operators for scientific-literature tables on Spark."""
