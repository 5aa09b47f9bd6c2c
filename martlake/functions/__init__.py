"""martlake.functions"""
