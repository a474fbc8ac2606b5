"""The recommender: ratings, the four recommendation lists, and their evaluation."""
