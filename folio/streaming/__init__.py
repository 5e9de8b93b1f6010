"""folio.streaming"""
