"""The three jobs: convert, preprocess, item features."""
