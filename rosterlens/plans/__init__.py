"""Named queries over the corpus, and their oracle SQL."""
