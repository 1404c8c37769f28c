"""Column expressions; nothing here touches a DataFrame's partitioning."""
