"""Complete jobs built from the operators: elections, star schema, indicators, reference lists."""
