"""tierflow: layered (raw -> trusted -> refined) analytics on weather and road routes.

Every operator takes and returns Spark DataFrames; the session is always the caller's.
"""
