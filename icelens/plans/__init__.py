"""Multi-operator plans: season statistics, rankings, cards and the full pipeline."""
