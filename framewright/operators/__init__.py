"""framewright.operators"""
