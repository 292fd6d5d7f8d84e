"""Operations of a training-data pipeline: ten operators, each a module of its own, and their registered queries."""
