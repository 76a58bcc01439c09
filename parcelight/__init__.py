"""Property lead scoring on Spark: raw appraisal tables to ranked leads."""
