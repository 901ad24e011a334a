"""orgloom: a PySpark-native engine for building and cleaning an organisation directory."""
