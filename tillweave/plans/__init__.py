"""Reports as data, and the runner that turns them into DataFrames."""
