from tradewind.functions.numeric import MONEY, QUANTITY, exact_ratio, round_money
from tradewind.functions.prefix import in_chunks, maxima_in_chunks, neighbour_values, occurrence_number, totals_before, totals_by_key, totals_in_chunks

__all__ = [
    "MONEY", "QUANTITY", "exact_ratio", "in_chunks", "maxima_in_chunks", "neighbour_values", "occurrence_number", "round_money", "totals_before",
    "totals_by_key", "totals_in_chunks",
]
