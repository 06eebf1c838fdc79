"""DataFrame -> DataFrame operators.  All are lazy: they build a logical plan
and run nothing, except where a docstring says a small statistic is computed
first (quantile fences, distinct category values)."""
