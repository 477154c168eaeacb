"""Operations of a training-data pipeline over a table of documents."""
