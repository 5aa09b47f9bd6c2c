"""martlake.streaming"""
