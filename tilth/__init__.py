"""Soil-moisture analytics on sensor readings, radar scenes and image pixels.

Every operator takes DataFrames and returns a DataFrame; nothing runs until
the caller asks for rows, except where a docstring says otherwise.
"""

__version__ = "0.1.0"
