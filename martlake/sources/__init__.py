"""martlake.sources"""
