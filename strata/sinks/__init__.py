"""Lake layout and writers."""
