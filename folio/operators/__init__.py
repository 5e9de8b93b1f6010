"""folio.operators"""
