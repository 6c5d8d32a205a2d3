"""corpusforge.streaming"""
