"""Published views and stored queries as functions over DataFrames."""
