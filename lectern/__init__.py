"""Lectern: reconciliation and corpus analytics expressed as Spark plans."""
