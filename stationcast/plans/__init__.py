"""Plans: the training job, the forecast job and the registered per-operator queries."""
