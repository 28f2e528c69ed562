"""corpusmill.operators"""
