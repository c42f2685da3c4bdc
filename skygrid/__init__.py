"""skygrid: satellite swaths, gridded cubes and station series as Spark DataFrames."""
