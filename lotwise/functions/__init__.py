"""Column expressions: text keys, rule classifiers, scores and wording."""
