"""Reports, profiles and end-to-end pipelines composed from the operators."""
