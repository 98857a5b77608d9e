"""Column functions: parsing, hashing, tokenizing and personal-data masking."""
