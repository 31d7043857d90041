"""The steps of the batch run, each a function of DataFrames."""
