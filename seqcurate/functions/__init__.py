"""Column expressions: accessions, labels, bins, hashes, quality flags, logits."""
