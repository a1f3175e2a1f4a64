"""Readers: text files as positioned lines, rolled chunks as a stream."""
