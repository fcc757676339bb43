"""Operations of a pipeline for training data."""
