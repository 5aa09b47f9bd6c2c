"""martlake.plans"""
