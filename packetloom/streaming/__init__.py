"""The same operators on streams: decoding and rules stay native, only keyed lookups hold state."""
