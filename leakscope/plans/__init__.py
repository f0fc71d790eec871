"""The jobs: typed core tables, quality checks, analyses, mart and report datasets."""
