"""The three steps: assemble the tables, build features and train, average the predictions."""
