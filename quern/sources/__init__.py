"""quern.sources"""
