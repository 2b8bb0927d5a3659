from ordertally.functions.messages import decode, encode, rejects, screen
from ordertally.functions.values import amount, customer_key

__all__ = ["amount", "customer_key", "decode", "encode", "rejects", "screen"]
