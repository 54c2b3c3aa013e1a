"""The four batch jobs (prepare, analyze, train, score) and the plans they are made of."""
