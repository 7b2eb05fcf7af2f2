"""Training-data operators: ten corpus-scale jobs and their registered queries."""
