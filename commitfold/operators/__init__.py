"""DataFrame operators: frames to operations, operations to tables, analysis."""
