"""DataFrame-in, DataFrame-out operators. They are lazy, but for the checks that must raise."""
