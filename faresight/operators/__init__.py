"""DataFrame -> DataFrame operators: staging, models/marts, ad-hoc queries,
quality checks, nested normalisation and batch sessionisation."""
