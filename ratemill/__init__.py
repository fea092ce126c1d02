"""Rates billing lines, rolls them up and produces an invoice-import sheet, on Spark."""
