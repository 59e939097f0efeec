"""DataFrame operators: tokens, postings, lists, search, browsing, word counts."""
