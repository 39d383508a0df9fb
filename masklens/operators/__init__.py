"""DataFrame -> DataFrame operators of the masking-log pipeline."""
