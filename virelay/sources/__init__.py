"""Readers and writers of the file formats of sequencing pipelines."""
