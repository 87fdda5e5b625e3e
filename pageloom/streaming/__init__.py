"""The same operators on arriving files."""
