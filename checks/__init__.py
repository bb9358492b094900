"""The given test tables read as price declarations, and the SQL each query is checked with."""
