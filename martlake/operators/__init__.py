"""martlake.operators"""
