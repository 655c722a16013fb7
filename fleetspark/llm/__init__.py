"""Operations of a training-data pipeline over text tables (README, "Training data")."""
