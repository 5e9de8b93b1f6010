"""folio.plans"""
