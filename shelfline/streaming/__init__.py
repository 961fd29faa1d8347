"""shelfline.streaming"""
