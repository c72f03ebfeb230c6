"""Column functions: text folds, word extraction, hashes and ids."""
