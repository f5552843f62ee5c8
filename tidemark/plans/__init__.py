"""The hourly weather and electricity data set, composed from the operators."""
