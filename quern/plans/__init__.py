"""quern.plans"""
