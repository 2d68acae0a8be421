"""The same operators on streams, and what a stream writes."""
