"""Column expressions: alleles, genotypes and text."""
