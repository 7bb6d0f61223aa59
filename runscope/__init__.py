"""Analytics over large logs of hyperparameter-tuning runs, on Spark DataFrames."""
