"""shelfline.sources"""
