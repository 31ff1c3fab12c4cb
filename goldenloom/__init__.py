"""goldenloom: mastering, quality checking and scoring of multi-source data as pure DataFrame functions."""
