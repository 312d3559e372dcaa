"""quern.functions"""
