"""corpusforge.plans"""
