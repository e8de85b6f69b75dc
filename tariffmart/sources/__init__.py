"""Where rows come from: stored tables, the given test tables, inline rows, generators."""
