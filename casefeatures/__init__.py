"""Case features on PySpark: nested detail tables in, one wide row per case out."""
