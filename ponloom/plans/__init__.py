"""The questions the network's users ask, one function each."""
