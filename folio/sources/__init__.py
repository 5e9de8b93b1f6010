"""folio.sources"""
