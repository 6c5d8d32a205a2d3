"""corpusforge.operators"""
