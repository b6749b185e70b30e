"""voxloom: a PySpark-native engine for annotating and filtering speech datasets."""
