"""Corpus metadata engine on PySpark: build, audit, project, diff and search document catalogues."""
