"""Spark-native analytics for governed language-model traffic.

Every operator is a plain function from DataFrame to DataFrame (or to Column);
nothing here owns a session, a scheduler or a store.
"""
