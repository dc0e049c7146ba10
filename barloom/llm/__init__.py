"""Operations for training-data pipelines: ten operators over documents, pages and vectors."""
