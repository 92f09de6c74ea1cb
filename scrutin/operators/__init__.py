"""Generic DataFrame operators. Every operator takes its column names as parameters."""
