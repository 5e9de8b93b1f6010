"""folio.functions"""
