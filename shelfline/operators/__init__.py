"""shelfline.operators"""
