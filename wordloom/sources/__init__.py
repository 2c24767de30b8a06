"""Reading corpora, word lists and TSV side inputs; writing results."""
