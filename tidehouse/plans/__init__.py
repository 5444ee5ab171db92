"""The warehouse's tables: dimension, detail and window layers."""
