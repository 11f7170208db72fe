"""The stateless operators applied to growing input folders."""
