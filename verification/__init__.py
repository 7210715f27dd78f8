"""Every result on the given tables, beside independent SQL for the same result."""
