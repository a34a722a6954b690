"""framewright.sources"""
