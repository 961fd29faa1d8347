"""shelfline.plans"""
