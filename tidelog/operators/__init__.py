"""DataFrame-to-DataFrame operators, shared by batch plans and streams."""
