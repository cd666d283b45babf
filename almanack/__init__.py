"""almanack: weekly sales, station climate and labour-market analyses as Spark jobs.

Every public function takes DataFrames and parameters and returns a DataFrame
or a Column; what to collect, show or write is up to the caller. Only the size
checks before a broadcast and the fit of k-means run jobs on the way.
"""
