"""Questions answered from the operators: business queries, reports, extracts, measures."""
