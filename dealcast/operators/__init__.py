"""Table-level operators over posts, the panel, predictions and scores."""
