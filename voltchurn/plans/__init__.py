"""Layer builders and job graphs: bronze, silver, gold, model, reports."""
