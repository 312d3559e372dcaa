"""quern.streaming"""
