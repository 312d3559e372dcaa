"""quern.operators"""
