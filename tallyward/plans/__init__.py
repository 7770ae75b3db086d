"""Table rules, normalization, questions, chart frames and the whole run."""
