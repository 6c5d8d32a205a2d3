"""corpusforge.functions"""
