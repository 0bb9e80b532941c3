"""Column expressions: periods, codes and text."""

from panelwright.functions import codes, periods, text

__all__ = ["codes", "periods", "text"]
