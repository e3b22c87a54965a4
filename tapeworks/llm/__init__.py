"""Operations of a training-data pipeline, each a function from DataFrames to a DataFrame.

Nothing outside this subpackage imports it; ``registry`` lists its queries.
"""
