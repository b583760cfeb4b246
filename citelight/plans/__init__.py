"""Table builds, runs, reports and quality checks made of the operators."""
