"""End-to-end plans composed from the operators (clean, forecast, classify, advise)."""
