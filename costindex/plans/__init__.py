"""Plans: staging views, marts, signals, score, checks and reports built from operators."""
