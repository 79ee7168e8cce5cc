"""Readers: lines of text, access logs, product records, ratings, load quality."""
