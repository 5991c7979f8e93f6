"""The read side: log search, trace search and assembly, span ranking, metric queries, the statement rollup."""
