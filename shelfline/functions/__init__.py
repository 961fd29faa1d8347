"""shelfline.functions"""
