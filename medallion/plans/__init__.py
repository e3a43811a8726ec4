"""Plans built from the library: node-graph runner, the HR application, and the driver's registered queries."""
