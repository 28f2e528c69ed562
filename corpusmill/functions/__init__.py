"""corpusmill.functions"""
