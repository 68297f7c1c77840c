"""Titles before a surname."""

# Titles that go before a surname, in four languages.
TITLES = ["Mr", "Ms", "Mrs", "Dr", "Mme", "Herr", "Frau", "Sr", "Sra"]
