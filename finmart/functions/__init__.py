"""Column functions and column-name functions; nothing here touches data eagerly."""
